"""tillroll: retail star-schema analytics expressed as Spark DataFrame operators.

Every operator takes and returns a ``pyspark.sql.DataFrame``; the work is planned by
Catalyst and executed by Spark. Money stays decimal, ratios are IEEE doubles computed
from exact sums, and no Python UDF sits on the data path.
"""

from tillroll.model import RetailModel
from tillroll.session import build_session, ensure_checkpoint_dir

__all__ = ["RetailModel", "build_session", "ensure_checkpoint_dir"]
