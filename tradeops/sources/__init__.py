from .publish import latest, publish
from .staging import stages
from .tables import Tables, ingest

__all__ = ["Tables", "ingest", "latest", "publish", "stages"]
