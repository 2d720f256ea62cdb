"""Training-data operators: language id, chat formatting, source mixing, secret
scans, quality rules, BPE, SimHash near-duplicates, token files, URL filters and
embedding near-duplicates. Nothing else in the library imports this package.
"""
