"""Entity x period panel analytics as composable Spark DataFrame operators."""

from panelloom.config import PanelKeys, PanelSpec

__all__ = ["PanelKeys", "PanelSpec"]
