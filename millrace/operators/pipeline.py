"""Declared lists of transformations, and named actions on a frame."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame

from millrace.catalogue import Catalogue
from millrace.operators.cleansing import TRANSFORMATIONS, CleansingContext, Transformation

logger = logging.getLogger(__name__)

Steps = Mapping | Sequence[Mapping]

# The order in which these steps are meant to be declared.
_EXPECTED_ORDER = ("RenameAttributes", "CastAttributes", "CalculateAttribute")


def register_transformation(name: str, function: Transformation) -> None:
    """Add a transformation of your own: ``(frame, argument, context) -> frame``."""
    if name in TRANSFORMATIONS:
        raise ValueError(f"transformation {name!r} exists already")
    TRANSFORMATIONS[name] = function


def flatten_steps(steps: Steps) -> list[tuple[str, object]]:
    """One ``{name: argument}`` mapping or a list of them, as pairs.

    Steps with an empty argument do not fire. Unknown names raise.
    """
    mappings: Iterable[Mapping] = [steps] if isinstance(steps, Mapping) else steps
    pairs = [(name, argument) for mapping in mappings for name, argument in mapping.items()]
    unknown = [name for name, _ in pairs if name not in TRANSFORMATIONS]
    if unknown:
        raise ValueError(f"unknown transformations {unknown}: choose from {sorted(TRANSFORMATIONS)}")
    return [(name, argument) for name, argument in pairs if argument not in (None, "", False, [], {})]


def order_warnings(steps: Steps) -> list[str]:
    """Steps declared out of rename, cast, calculate order.

    A calculation may come first on purpose (the cast of its result), so this
    only warns.
    """
    names = [name for name, _ in flatten_steps(steps)]
    found = []
    for earlier, later in zip(_EXPECTED_ORDER, _EXPECTED_ORDER[1:]):
        if earlier in names and later in names and names.index(later) < names.index(earlier):
            found.append(f"{later} comes before {earlier}")
    return found


def apply_pipeline(
    df: DataFrame,
    steps: Steps,
    catalogue: Catalogue | None = None,
    context: CleansingContext | None = None,
) -> DataFrame:
    """Fold the declared steps over the frame; nothing runs until an action."""
    context = context or CleansingContext(catalogue=catalogue)
    for warning in order_warnings(steps):
        logger.warning("cleansing steps: %s", warning)
    for name, argument in flatten_steps(steps):
        df = TRANSFORMATIONS[name](df, argument, context)
    return df


Action = Callable[..., DataFrame]
_ACTIONS: dict[str, Action] = {}


def register_action(name: str, function: Action) -> Action:
    """Make ``function(frame, job)`` callable by name from ActionFunctions."""
    _ACTIONS[name] = function
    return function


def find_actions(names: Sequence[str] | None) -> list[Action]:
    """The registered actions of a properties document; raises on gaps."""
    if not names:
        raise ValueError("Extended.Cleanse.ActionFunctions is missing or empty")
    absent = [name for name in names if name not in _ACTIONS]
    if absent:
        raise ValueError(f"actions {absent} are not registered: call register_action first")
    return [_ACTIONS[name] for name in names]
