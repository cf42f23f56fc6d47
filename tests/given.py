"""Where the given tables lie."""

TABLES = "/root/testdata/sf0.001"
