"""Catalogue enrichment on Spark: nested product documents in, enriched documents out.

Every operator takes and returns a ``DataFrame`` (or a ``Column``), so each can be
used alone or chained with ``DataFrame.transform``. ``plans.enrichment`` chains them.
"""
