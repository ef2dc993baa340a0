"""Transaction risk, regulatory reporting and data-quality operators for Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function.  Import from the
sub-packages: ``functions`` (columns), ``operators`` (reusable relational
building blocks), ``sources`` (reading and writing), ``plans`` (the datasets)
and ``streaming`` (incremental runs).
"""
