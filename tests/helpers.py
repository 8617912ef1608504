"""Paths and small builders shared by the test modules."""

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def sentences_text(a, b):
    return " ".join(f"S{i}." for i in range(a, b + 1))
