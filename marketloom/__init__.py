"""Marketplace analytics as Spark jobs: recommendations, demand, quality and monitoring."""
