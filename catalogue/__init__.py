"""The checked queries: operators over tables derived from the test tables."""
