from ledgerline.sources.registry import SourceRegistry  # noqa: F401
from ledgerline.sources.standins import StandIns  # noqa: F401
