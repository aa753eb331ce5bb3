"""Column expressions: everything here stays inside the JVM."""

from .clean import *  # noqa: F401,F403
from .codes import *  # noqa: F401,F403
from .text import *  # noqa: F401,F403
