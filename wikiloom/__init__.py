"""Wiki corpus engine: page dumps to clean, queryable tables with Spark.

Every public function takes and returns a DataFrame or a Column, builds a lazy
plan, and leaves scheduling, partitioning and code generation to Spark.
"""
