from ledgerline.functions.money import exact_sum, hundredths, require_ansi

__all__ = ["exact_sum", "hundredths", "require_ansi"]
