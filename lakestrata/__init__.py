"""Spark jobs that turn raw replicated tables into a clean detail layer.

``functions``  column expressions
``sources``    table specs, readers, DDL, views over the test tables
``operators``  DataFrame -> DataFrame transforms and the batch jobs on tables
``streaming``  long-running and bounded loads
``plans``      the concrete tables and models built from the operators
"""
