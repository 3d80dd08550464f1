"""Column functions whose meaning differs from Spark's defaults."""

from sparkmart.functions.dates import *  # noqa: F401,F403
from sparkmart.functions.keys import *  # noqa: F401,F403
from sparkmart.functions.nulls import *  # noqa: F401,F403
from sparkmart.functions.text import *  # noqa: F401,F403
from sparkmart.functions.variant import *  # noqa: F401,F403
