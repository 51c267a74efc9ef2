"""Customer, campaign and sales-team analytics as Spark DataFrame functions.

Every public function takes DataFrames (and plain parameters) and returns a lazy
DataFrame.  See README.md for the layout and the design rules.
"""
