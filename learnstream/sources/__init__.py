from learnstream.sources.adapters import FEEDS, province_ranges  # noqa: F401
from learnstream.sources.parse import PARSERS  # noqa: F401
