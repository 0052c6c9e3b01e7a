"""lakeshore: a PySpark-native lakehouse for a B2B shop.

Order documents and web logs land as files, stream into bronze tables with a
quarantine for bad records, become typed silver tables, keep dimension tables
current by keyed upserts with change feeds, get checked by declarative quality
rules, and feed the marketing and sales reports.  Everything is DataFrame /
Spark SQL / Structured Streaming code; there is no row-at-a-time Python in the
core.
"""

__version__ = "0.1.0"
