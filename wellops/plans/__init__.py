"""The data jobs: raw, validated and aggregated layers, forecast, operational queries."""
