from ledgerline.sources.tables import table

__all__ = ["table"]
