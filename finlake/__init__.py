"""finlake: a Spark-first finance lakehouse engine.

Raw multi-version transaction files become a clean silver table (latest
version per id, completed rows only, amounts in US dollars, quality gate,
keyed upsert); customers are scored by recency, frequency and monetary
value; monthly totals are reconciled against an external source; a JSON
event stream is ingested with idempotent micro-batch upserts.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's
own relational operators and built-in expressions.
"""

__version__ = "0.1.0"
