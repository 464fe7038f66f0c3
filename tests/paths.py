"""Where the tests find the driver tables."""

SF_SMALL = "/root/testdata/sf0.001"
