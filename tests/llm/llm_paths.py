"""Folders of the test tables."""

SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"
