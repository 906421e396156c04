"""DataFrame operators: every function takes and returns DataFrames."""

from .aggregates import *  # noqa: F401,F403
from .bitmaps import *  # noqa: F401,F403
from .filters import *  # noqa: F401,F403
from .joins import *  # noqa: F401,F403
from .project import *  # noqa: F401,F403
from .reshape import *  # noqa: F401,F403
from .sets import *  # noqa: F401,F403
from .skew import *  # noqa: F401,F403
from .themes import *  # noqa: F401,F403
from .windows import *  # noqa: F401,F403
