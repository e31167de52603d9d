"""All queries of the library by name, with SQL for DuckDB where SQL can express them."""

from .plans import calibration_queries, header_queries, imaging_queries, photometry_queries, product_queries, wcs_queries  # noqa: F401  they add their queries to those of the survey
from .plans.survey_queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
