from ledgerline.plans.price_summary import PRICE_SUMMARY_SQL, price_summary

__all__ = ["PRICE_SUMMARY_SQL", "price_summary"]
