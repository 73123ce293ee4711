from .files import Files
from .publication import Publication, recover
from .sinks import published, write_report
from .staging import Staging, scope, scratch_dir
from .workbooks import decode_workbooks, find_workbooks, land_workbooks

__all__ = [
    "Files",
    "Publication",
    "Staging",
    "decode_workbooks",
    "find_workbooks",
    "land_workbooks",
    "published",
    "recover",
    "scope",
    "scratch_dir",
    "write_report",
]
