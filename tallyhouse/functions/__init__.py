"""Column functions shared by the plans. All stay inside the JVM."""

from .dates import days_between, file_date, hours_between, mean_days
from .money import MONEY, exact_average
from .text import file_extension, file_stem, null_tokens, plain_text, title_words

__all__ = [
    "MONEY", "days_between", "exact_average", "file_date", "file_extension", "file_stem",
    "hours_between", "mean_days", "null_tokens", "plain_text", "title_words",
]
