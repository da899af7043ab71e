"""Larder: DataFrame operators and plans for meal-planning data.

``larder.functions``  column expressions
``larder.operators``  DataFrame -> DataFrame operators
``larder.sources``    schemas of the input tables, table binding, staging
``larder.plans``      the recipe pool, stage by stage and as a whole
"""
