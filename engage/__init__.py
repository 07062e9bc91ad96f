"""Customer-analytics operators expressed as Spark DataFrame transformations."""

from engage.session import build_session, configure, scratch_dir

__all__ = ["build_session", "configure", "scratch_dir"]
