"""Event-collection reports and lake-file joins as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; nothing but bounded,
single-row facts (a header line, a key index, a measured size) ever reaches
the driver.
"""
