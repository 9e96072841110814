"""All registered queries; importing a plan module registers its queries."""

from docloom.plans import ingest, lengths, metrics, pages, sections, star, streams, summaries, text  # noqa: F401
from docloom.plans.registry import ORACLES, QUERIES  # noqa: F401
