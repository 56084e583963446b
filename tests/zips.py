"""ZIP files for tests."""

import os
import zipfile

from orderlake.schemas import HEADER_MAP

HEADER = ",".join(HEADER_MAP)


def line(order_id, region="Asia", order_date="1/2/2020", units="5", country="Japan"):
    return (
        f"{region},{country},Fruits,Online,H,{order_date},{order_id},1/9/2020,{units},"
        "9.33,6.92,46.65,34.60,12.05"
    )


def write_zip(root, key, members, modified=None):
    """`members` maps name -> text or bytes; a text alone is taken for `sales.csv`."""
    path = os.path.join(root, key)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if isinstance(members, (str, bytes)):
        members = {"sales.csv": members}
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            info = zipfile.ZipInfo(name, (2026, 1, 1, 0, 0, 0))
            info.compress_type = zipfile.ZIP_DEFLATED
            archive.writestr(info, text)
    if modified is not None:
        os.utime(path, (modified, modified))
    return path


def csv(*lines, header=HEADER):
    return "\n".join([header, *lines]) + "\n"
