"""Training-data operators: URL filters, line and near-duplicate removal, decontamination, language
identification, WARC derivatives, main-text extraction, secret scans, exact top-k search and source mixing.

Nothing else in the package imports this subpackage.
"""
