"""quarry: a Spark-native engine for extracting, filtering, typing, exporting,
profiling and monitoring tabular datasets.

Every operator is a DataFrame -> DataFrame function or a Column builder made
from Spark's built-in functions, so Catalyst can push filters into the scan,
prune columns and keep work inside whole-stage codegen.
"""

from quarry.session import build_session, shared_dir, scratch_path

__all__ = ["build_session", "shared_dir", "scratch_path"]
