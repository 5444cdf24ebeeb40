"""Operators of a training-data pipeline: joins on word shingles, licences, token files, mixing,
nearest neighbours, WARC, toxicity, packing and URL rules.

Nothing outside this folder imports it.
"""
