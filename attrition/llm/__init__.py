"""Operators for large training-data corpora: token counts, line and n-gram
de-duplication, packing, fingerprints, licences, WARC, decontamination,
toxicity and secrets. Nothing outside this subpackage imports it."""
