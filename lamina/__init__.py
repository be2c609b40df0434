"""lamina: mesh, texture, ledger and measurement pipelines as Spark relations."""

from lamina.operators.gates import Thresholds, judged, summary, verdict
from lamina.operators.image import delivered
from lamina.operators.measures import assembled, sheet_agreement
from lamina.operators.raster import address_map
from lamina.session import build_session
from lamina.versions import VERSIONS

__version__ = VERSIONS["package_version"]
__all__ = ["Thresholds", "VERSIONS", "address_map", "assembled", "build_session", "delivered", "judged", "sheet_agreement", "summary", "verdict"]
