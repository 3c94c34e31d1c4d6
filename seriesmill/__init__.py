"""Many-series sales analytics and forecasting as ordinary Spark DataFrame work."""

from seriesmill.operators.forecast import ForecastSpec, forecast, forecast_components

__all__ = ["ForecastSpec", "forecast", "forecast_components"]
