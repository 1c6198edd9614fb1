from tierworks.functions.columns import MONEY, exact, ingest_instant, newest_first, oldest_first, sortable

__all__ = ["MONEY", "exact", "ingest_instant", "newest_first", "oldest_first", "sortable"]
