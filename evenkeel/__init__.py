"""Reconciled finance analytics and document archives as Spark DataFrame jobs."""
