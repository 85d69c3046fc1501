"""Column -> Column rules. Nothing here runs a Spark job."""

from .devices import *  # noqa: F401,F403
from .measures import *  # noqa: F401,F403
from .memory import *  # noqa: F401,F403
from .prices import *  # noqa: F401,F403
from .text import *  # noqa: F401,F403
