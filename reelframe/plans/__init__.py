"""Plan-level helpers: storage for intermediate tables,
session settings for scale, and plan inspection."""

from .config import SCALE_DEFAULTS, apply_defaults
from .inspect import count_nodes, formatted_plan, physical_plan, python_nodes
from .storage import checkpoint_dir, drop_table, dropped_tables, ensure_checkpoint_dir, materialize, shared_folder

__all__ = [
    "SCALE_DEFAULTS", "apply_defaults", "checkpoint_dir", "count_nodes", "drop_table", "dropped_tables",
    "ensure_checkpoint_dir", "formatted_plan", "materialize", "physical_plan", "python_nodes",
    "shared_folder",
]
