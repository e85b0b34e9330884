"""Expression builders.

Each function takes and returns Spark SQL expression text; the caller hands the finished
text to ``F.expr``. One expression then costs one call from Python, however deep it is,
and everything stays in the JVM.
"""
