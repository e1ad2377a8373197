"""The folder of the small tables that tests read."""

SMALL = "/root/testdata/sf0.001"
