"""Training-data operators: URL filter, quality classifier, decontamination,
token counts, near-duplicate removal, token files, fingerprints and mixing.

One module per operator; ``queries.py`` registers them.  Nothing else in the
library imports this subpackage.
"""
