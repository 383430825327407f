"""Column-level functions (pure ``Column -> Column``), all JVM built-ins."""

from derrick.functions.exprs import *  # noqa: F401,F403
