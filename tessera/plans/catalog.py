"""All registered queries of the tabular operators, and their SQL."""

from __future__ import annotations

from tessera.plans import aggregates, columns, evaluation, folds, joins, ledger, models, scalars, texts, transforms, windows  # noqa: F401
from tessera.plans.registry import ORACLES, QUERIES  # noqa: F401
