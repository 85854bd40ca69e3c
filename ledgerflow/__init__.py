"""ledgerflow: B2B sales and customer analytics on Spark DataFrames."""

from .session import build_session, ensure_checkpoint_dir, scratch_path  # noqa: F401
