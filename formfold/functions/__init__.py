"""Column builders: every function takes columns and returns a column."""

from .arrays import *  # noqa: F401,F403
from .flags import *  # noqa: F401,F403
from .numbers import *  # noqa: F401,F403
from .structs import *  # noqa: F401,F403
from .text import *  # noqa: F401,F403
from .times import *  # noqa: F401,F403
