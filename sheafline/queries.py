"""All registered queries of the document operators and their SQL."""

from __future__ import annotations

from sheafline import catalog
from sheafline.catalog import answers, images, layout, state, streams, text, workflow  # noqa: F401  they register

QUERIES = catalog.QUERIES
ORACLES = catalog.ORACLES
