"""Column expressions and small projections. All of them stay JVM-side."""

from cohortloom.functions.bands import age_band, bucket, bucket_tests, decode, encode_label
from cohortloom.functions.hashing import order_hash, row_key, signature, with_signature
from cohortloom.functions.numbers import inside, is_text, missing, parse, parsed_once, with_numbers, with_whole
from cohortloom.functions.text import clean_label, is_blank, match_label, strip, title

__all__ = [
    "age_band",
    "bucket",
    "bucket_tests",
    "clean_label",
    "decode",
    "encode_label",
    "inside",
    "is_blank",
    "is_text",
    "match_label",
    "missing",
    "order_hash",
    "parse",
    "parsed_once",
    "row_key",
    "signature",
    "strip",
    "title",
    "with_numbers",
    "with_signature",
    "with_whole",
]
