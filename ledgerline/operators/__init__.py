from ledgerline.operators.joins import *  # noqa: F401,F403
from ledgerline.operators.sets import *  # noqa: F401,F403
from ledgerline.operators.params import *  # noqa: F401,F403
