"""Training-data operators: tokens out, mixing, chat windows, language, quality,
duplicates, benchmark leaks, language-model scores and toxicity.

Nothing else in the library imports this subpackage.
"""
