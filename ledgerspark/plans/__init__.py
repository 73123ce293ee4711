from . import reports

__all__ = ["reports"]
