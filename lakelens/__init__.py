"""Query, page, save and analyse the files of a data lake with PySpark."""
