"""Command line: runs a catalog query or an operator over files.

    python -m gridloom list
    python -m gridloom query NAME TABLES OUT
    python -m gridloom sql NAME
    python -m gridloom inventory LAS_FOLDER OUT
    python -m gridloom treetops CELLS OUT [--resolution 0.5 --bands SPEC --smooth 1]
    python -m gridloom crowns CELLS OUT [--min-height 2]
    python -m gridloom terrain CELLS OUT [--cell 0.5]
    python -m gridloom tiles XMIN YMIN XMAX YMAX OUT [--size 200 --overlap 15 --cell 0.5]
    python -m gridloom overlaps LEFT RIGHT OUT
    python -m gridloom compare LEFT RIGHT OUT
    python -m gridloom extract LAS_FOLDER XMIN YMIN XMAX YMAX OUT
    python -m gridloom raster CELLS FOLDER XMIN YMAX [--cell 0.5]

Tables are Parquet; an output that exists is refused.
"""

from __future__ import annotations

import argparse


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gridloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *places: str, **options: object) -> None:
        s = sub.add_parser(name)
        for a in places:
            s.add_argument(a, type=float if a in ("xmin", "ymin", "xmax", "ymax") else str)
        for a, default in options.items():
            s.add_argument("--" + a.replace("_", "-"), type=type(default), default=default)

    box = ("xmin", "ymin", "xmax", "ymax")
    command("list")
    command("query", "name", "tables", "out")
    command("sql", "name")
    command("inventory", "folder", "out")
    command("treetops", "cells", "out", resolution=0.5, bands="2-6:1.0, 6-12:1.5, 12-20:2.0, 20-:2.5", smooth=1)
    command("crowns", "cells", "out", min_height=2.0)
    command("terrain", "cells", "out", cell=0.5)
    command("tiles", *box, "out", size=200.0, overlap=15.0, cell=0.5)
    command("overlaps", "left", "right", "out")
    command("compare", "left", "right", "out")
    command("extract", "folder", *box, "out")
    command("raster", "cells", "folder", "xmin", "ymax", cell=0.5)
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    if a.command in ("list", "sql"):
        from gridloom.plans import catalog

        print("\n".join(sorted(catalog.queries())) if a.command == "list" else catalog.oracle_sql().get(a.name, "no SQL expresses this query"))
        return
    from pyspark.sql import functions as F

    from gridloom.operators import polygons, rasters, tiles
    from gridloom.session import session
    from gridloom.sources import files, las, rasters as tiff

    if hasattr(a, "out"):
        files.new_output(a.out)
    spark = session()
    read = spark.read.parquet
    if a.command == "query":
        from gridloom.plans import catalog

        out = catalog.queries()[a.name](spark, a.tables)
    elif a.command == "inventory":
        las.register(spark)
        out = las.inventory(spark, a.folder)
    elif a.command == "treetops":
        out = rasters.treetops(read(a.cells), a.resolution, rasters.parse_bands(a.bands), a.smooth)
    elif a.command == "crowns":
        out = rasters.crowns(read(a.cells), a.min_height)
    elif a.command == "terrain":
        out = rasters.terrain(read(a.cells), a.cell)
    elif a.command == "tiles":
        out = tiles.tile_grid(spark, tiles.Extent(a.xmin, a.ymin, a.xmax, a.ymax), a.size, a.overlap, a.cell)
    elif a.command == "overlaps":
        out = polygons.overlaps(read(a.left), read(a.right))
    elif a.command == "compare":
        out = polygons.compare_layers(read(a.left), read(a.right))
    elif a.command == "extract":
        las.register(spark)
        points = spark.read.format("las").load(a.folder)
        inside = points.where(F.col("x").between(a.xmin, a.xmax) & F.col("y").between(a.ymin, a.ymax))
        inside.write.format("las").mode("append").save(a.out)
        return
    else:
        print(tiff.write_tiles(read(a.cells), a.folder, a.xmin, a.ymax, a.cell).count(), "files")
        return
    out.write.parquet(a.out)


if __name__ == "__main__":
    main()
