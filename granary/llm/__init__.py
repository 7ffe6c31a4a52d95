"""Training-data operators: language mixture, packing, curriculum mixing, sharding,
token counts, robust quality rules, SimHash, line and substring dedup, TIFF columns,
spelling variants, personal data and ranked search.

Nothing outside this subpackage imports it.
"""
