"""Training-data operators: fingerprints, token counts, token files, quality,
secrets, line dedup, toxicity, decontamination, mixing and SimHash dedup.

Nothing else in the library imports this subpackage.
"""
