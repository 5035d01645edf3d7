"""cascara: Spark-native operators for counting, item-set mining, segmentation,
clustering, recommendation and decision trees.

Every operator is a function ``f(DataFrame, ...) -> DataFrame`` built from
Spark SQL expressions and MLlib estimators. Operators are lazy unless their
docstring says otherwise (ML fits and bounded name lookups are the only
documented actions).
"""

from cascara.session import build_session, scratch_path, ensure_checkpoint_dir

__all__ = ["build_session", "scratch_path", "ensure_checkpoint_dir"]
