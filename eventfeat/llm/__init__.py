"""Operators of a training-data pipeline (quality, packing, decontamination, HTML
extraction, near-duplicate join, repeated-text removal, line dedup, chat formatting,
secret scans, URL filters, periodic runs, conversation repair, SentencePiece encoding).
Nothing else in the library imports this subpackage."""
