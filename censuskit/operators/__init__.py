"""Operators: DataFrame -> DataFrame jobs (rates, scores, rankings,
segments, trends, distributions, correlation, normalisation, quality)."""
