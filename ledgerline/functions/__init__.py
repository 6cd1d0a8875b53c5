from ledgerline.functions.exprs import *  # noqa: F401,F403
from ledgerline.functions.timefilters import *  # noqa: F401,F403
