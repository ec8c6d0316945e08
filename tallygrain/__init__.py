"""Customer behaviour and risk analytics on PySpark."""

from tallygrain.columns import TxColumns
from tallygrain.session import build_session, materialize, use_utc

__all__ = ["TxColumns", "build_session", "materialize", "use_utc"]
