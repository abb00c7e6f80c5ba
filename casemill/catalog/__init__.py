"""Named queries over the given tables, each with an equivalent SQL statement where one exists."""

from . import access, case_queries, contract_queries, file_queries, intake_queries, market_queries, model_queries, quality_queries, stream_queries, weather_queries
from .registry import QUERIES, SQL

FLAGSHIP = "ohlcv_1min"

__all__ = ["FLAGSHIP", "QUERIES", "SQL", "access", "case_queries", "contract_queries", "file_queries", "intake_queries", "market_queries", "model_queries", "quality_queries", "stream_queries", "weather_queries"]
