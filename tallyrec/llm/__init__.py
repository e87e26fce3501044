"""Training-data operators and the corpus pipeline (see README, "Training data").

Nothing else in the library imports this package; it may be removed as a whole.
"""
