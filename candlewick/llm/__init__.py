"""Training-data operators: toxicity, near-duplicates, token counts, LM scores,
language ID, quality and URL rules, BPE and source mixing.

Nothing else in the library imports this subpackage.
"""
