"""Operators for preparing text corpora: output files, quality rules,
de-duplication, mixing, secret scans, token counts, byte-pair encoding,
fingerprints and HTML extraction. Nothing else in the library imports it."""
