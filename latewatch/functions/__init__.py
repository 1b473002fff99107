"""Column expressions shared by the operators (all JVM-side built-ins)."""

from .columns import *  # noqa: F401,F403
from .rounding import *  # noqa: F401,F403
