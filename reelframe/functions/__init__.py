"""Column-level building blocks (no actions, no UDFs)."""

from .json import entry_names, exploded_name, parsed_entries
from .predicates import above, all_of, nonzero, not_blank
from .text import delimited, suffixed, unpadded_date

__all__ = [
    "above", "all_of", "delimited", "entry_names", "exploded_name", "nonzero",
    "not_blank", "parsed_entries", "suffixed", "unpadded_date",
]
