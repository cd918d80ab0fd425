"""stormcab: a Spark-native trip and weather warehouse.

Landed trip Parquet, weather documents and a zone lookup become typed raw
tables, cleaned staging views, a star schema (hourly calendar, zone and
weather dimensions; trip, hourly-demand, fare-revenue and weather-impact
facts), quality checks and dashboard queries -- all DataFrame expressions
planned by Catalyst.
"""

__version__ = "0.1.0"
