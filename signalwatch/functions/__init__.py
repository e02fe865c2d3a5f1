from signalwatch.functions.columns import *  # noqa: F401,F403
from signalwatch.functions.columns import __all__  # noqa: F401
