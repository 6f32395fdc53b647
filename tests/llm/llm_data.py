"""Where the given tables are."""

SF = "/root/testdata/sf0.001"
