"""Column -> Column functions (scalar rules of the warehouse)."""

from delaystar.functions.columns import *  # noqa: F401,F403
from delaystar.functions.identity import duplicate_key, observation_id, uuid5  # noqa: F401
