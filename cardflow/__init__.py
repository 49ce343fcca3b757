"""cardflow: Spark DataFrame operators and report jobs for daily card-operations reporting.

Every operator returns a lazy ``DataFrame`` (or ``Column``); Catalyst plans the work.
Business dates are Python values turned into literals, so dates fold into scan filters.
"""

from cardflow.functions.dates import BusinessDate

__all__ = ["BusinessDate"]
