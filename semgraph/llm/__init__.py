"""Training-data operators: filtering, deduplication, tokenizing, packing, scoring and search.

Nothing outside this subpackage imports it.  Spark ships functions of these
modules by reference, so a cluster needs the package on its executors
(``--py-files`` or an installed wheel).
"""
