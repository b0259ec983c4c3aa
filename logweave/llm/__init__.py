"""Training-data pipeline operators: near-duplicate detection, decontamination,
token counts, source mixing, toxicity, chat formatting, HTML extraction,
licence scans, substring removal and quality rules.

Nothing outside this subpackage imports it.
"""
