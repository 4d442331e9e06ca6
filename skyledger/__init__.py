"""PySpark-native analytics for operational data: quality, cleaning, star schemas, KPI measures, what-if projections."""
