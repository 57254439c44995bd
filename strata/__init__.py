"""strata: governed medallion analytics for payment transactions on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column``) function built
from Spark SQL built-ins, so Catalyst plans, prunes and pushes down across the
whole chain bronze -> silver -> quarantine -> gold -> observability.
"""

__version__ = "0.1.0"
