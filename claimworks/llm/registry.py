"""The registered queries of this subpackage and their SQL twins."""

from importlib import import_module

MODULES = ["ngram_join", "warc", "packing", "bpe", "pii", "syncmers", "licenses", "topk", "html_text", "toxicity",
           "collocations", "resampling", "exact_dedup"]


def _collect(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        merged.update(getattr(import_module(f"claimworks.llm.{name}"), attribute, {}))
    return merged


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict:
    return _collect("SQL")
