"""firmlink: company-entity unification on Spark DataFrames.

Builds one company table from a business register (XML records keyed by a
company number) and crawled web pages: staging with quarantine and
insert-if-absent loads, name normalisation, exact and blocked fuzzy matching
with confidence bands, verdicts for borderline pairs, and one best row per
(company number, domain).
"""

import sys

from pyspark import cloudpickle as _cloudpickle

# Python code of this package that runs in tasks (the similarity UDF, the
# confirmation mapper) is shipped by value, so Python workers need no
# installed copy of the package (also when the driver imported it from a
# path that executors do not have).
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

from firmlink.config import MatchConfig  # noqa: E402

__all__ = ["MatchConfig"]
