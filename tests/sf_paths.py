"""Folders of the shared test tables."""

SF_SMALL = "/root/testdata/sf0.001"
