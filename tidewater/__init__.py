"""Medallion order analytics on Spark: ingest, change capture, upserts, reports and governance."""
