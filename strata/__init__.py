"""Layered batch analytics on Spark: raw text -> typed and flagged -> star schema -> KPIs and audits."""
