from .balances import KeptBalances
from .folder import FolderStream, refresh, run_stream
from .gate import due_reports
from .landing import land, landed_rows, withdraw

__all__ = ["FolderStream", "KeptBalances", "due_reports", "land", "landed_rows", "refresh", "run_stream", "withdraw"]
