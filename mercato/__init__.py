"""mercato: commerce analytics (sessions, RFM, funnels, cohorts, basket
affinity, star schema with SCD2, data quality, streaming) on Spark DataFrames."""

__version__ = "0.1.0"
