"""Lead/lag indicator analytics over keyed panels of time series, on Spark."""
