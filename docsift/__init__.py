"""docsift: document search, aggregation and maintenance as lazy Spark plans."""

from .functions import mapping as MP  # noqa: F401
from .functions import predicates as P  # noqa: F401
from .operators import bucket_series as PL  # noqa: F401
from .operators import buckets as B  # noqa: F401
from .operators import metrics as M  # noqa: F401
from .operators import text as X  # noqa: F401
from .operators import write as W  # noqa: F401
from .plans.search import Resource, aggs, execute, query, search, select_fields, sort_on  # noqa: F401
from .session import build_session  # noqa: F401
