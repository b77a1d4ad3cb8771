"""Registered queries over the driver tables."""

from sitewise.plans.registry import ORACLE, QUERIES  # noqa: F401
from sitewise.plans import q_allocation  # noqa: F401
from sitewise.plans import q_ranking  # noqa: F401
from sitewise.plans import q_shape  # noqa: F401
from sitewise.plans import q_quality  # noqa: F401
from sitewise.plans import q_history  # noqa: F401
from sitewise.plans import q_decode  # noqa: F401
from sitewise.plans import q_stream  # noqa: F401
from sitewise.plans import q_spatial  # noqa: F401
from sitewise.plans import q_analysis  # noqa: F401
from sitewise.plans import q_checks  # noqa: F401
from sitewise.plans import q_profile  # noqa: F401
from sitewise.plans import q_ingest  # noqa: F401
from sitewise.plans import q_layers  # noqa: F401
from sitewise.plans import q_warehouse  # noqa: F401
