"""duskline: technology-lifecycle risk analytics on Spark DataFrames.

Every transform is a plain ``DataFrame -> DataFrame`` or ``Column -> Column``
function. Dates that the calculation depends on (``as_of``, ``run_ts``) are
arguments, so a plan gives the same rows whenever it is run.
"""
