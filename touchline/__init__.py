"""Season analytics on Spark: loads, marts, history, graph, KPIs and data checks as DataFrame operators."""

from touchline.config import Settings
from touchline.session import get_session

__all__ = ["Settings", "get_session"]
