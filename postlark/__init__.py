"""Social-post analytics as Spark jobs.

``sources``   typed readers and parquet writers
``functions`` Column expressions (text, dates, URLs, topic rules)
``operators`` DataFrame in, DataFrame out
``plans``     whole jobs and reports composed from the operators
"""
