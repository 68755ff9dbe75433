"""All registered queries."""

from . import admission, decisions, evidence, poses, recapture, site_audits, structure, upkeep  # noqa: F401
from .registry import ORACLE_SQL, QUERIES  # noqa: F401
