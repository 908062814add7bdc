"""The whole release over a folder: BASE/bronze/ano=YYYY -> BASE/releases/VERSION/{silver,gold,qualidade}.

python -m surveyloom.run BASE [--mapping JSON] [--step silver|gold|all] [--delivery FOLDER] [--no-line-breaks]
                              [--expected JSON | --no-volume-gate] [--database NAME] [--keep N] [--editions E ...]
                              [--quarantine]
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from surveyloom.plans import contract, release, versions
from surveyloom.plans import vocabulary as v
from surveyloom.sources import store
from surveyloom.sources.editions import edition_path, land_delivery, landed_editions, read_edition
from surveyloom.sources.headers import as_headers, older_editions, read_mapping, write_mapping

LAYERS = ("silver_core", "silver_serie_longa")


def run(
    spark: SparkSession, base: str, step: str = "all", mapping: str | None = None, gate: bool = True,
    line_breaks: bool = True, expected: Mapping[int, int] | None = None, database: str | None = None, keep: int = 2,
    editions: Sequence[int] = (), quarantine: bool = False,
) -> dict[str, int]:
    """Rows per mart written; empty if only silver was asked for.

    Everything is written into the folders of a new version, which becomes current at the end; readers find tables by
    `versions.table_path`. A run that fails anywhere changes nothing they see. Versions that neither the current
    release nor the `keep` - 1 before it read are deleted. A whole run (`all`) also writes the quality tables and
    the mapping. Layers and marts are views of the session afterwards, and external tables of `database`.
    `line_breaks`: answers may hold line breaks; files are split all the same. Row counts are held to `expected`, by
    default to those of the published survey, which a mapping of its own has to replace; `gate` switches that off.
    `editions`: only these changed since the current release, so marts count them alone and keep its other counts.
    `quarantine`: rows that break a rule of `contract.core_rules` go aside in the write of the core layer, whose table then
    has one more column (`violacoes`, empty); layers and marts are without them, `contract.read_quarantine` reads them from
    table `versions.CHECKED`, and a whole run counts them by rule (`qualidade/violacoes`). A later run of the silver
    step without it ends both tables.
    """
    bronze, version = f"{base}/bronze", versions.new_version()
    folder, tables, rows = versions.version_folder(base, version), {}, {}
    dropped: tuple[str, ...] = ()
    aside = None
    if step in ("silver", "all"):
        headers = as_headers(read_mapping(spark, mapping)) if mapping else v.CORE_HEADERS | v.HISTORY_HEADERS
        history = older_editions(spark, mapping) if mapping else set(v.HISTORY_EDITIONS)
        if odd := landed_editions(spark, bronze) ^ set(headers):
            raise ValueError(f"editions with files but no mapping, or a mapping but no files: {sorted(odd)}")
        core = {e: headers[e] for e in sorted(set(headers) - history)}
        older = {e: headers[e] for e in sorted(history)}
        raw = {e: read_edition(spark, bronze, e, line_breaks) for e in headers}
        layers = release.build_silver(
            spark, {e: raw[e] for e in core}, {e: raw[e] for e in older}, core, older, f"{folder}/silver",
            (expected or v.EXPECTED_ROWS) if gate else None, contract.core_rules() if quarantine else None)
        tables |= {f"silver/{name}": f"silver/{name}" for name in LAYERS}
        dropped = versions.CHECKED, "qualidade/violacoes"
        if quarantine:
            tables |= {"silver/silver_core": f"silver/silver_core/{contract.GOOD_FOLDER}", versions.CHECKED: "silver/silver_core"}
            aside = contract.read_quarantine(spark, f"{folder}/silver/silver_core")
    else:
        layers = [versions.read_released(spark, base, f"silver/{name}") for name in LAYERS]
    written: dict[str, int] = {}
    if step in ("gold", "all"):
        before = versions.table_path(base, "gold/cubo") if editions else None
        written = release.publish_marts(*layers, f"{folder}/gold", before, editions)
        tables |= {f"gold/{name}": f"gold/{name}" for name in (*written, "cubo")}
        rows |= {f"gold/{name}": n for name, n in written.items()}
    if step == "all":
        paths = {e: edition_path(bronze, e) for e in sorted(headers)}
        checked = release.publish_quality(raw, *layers, f"{folder}/qualidade", written, paths, aside)
        write_mapping(spark, core, older, f"{folder}/qualidade/mapeamento")
        tables |= {f"qualidade/{name}": f"qualidade/{name}" for name in (*checked, "mapeamento")}
        rows |= {f"qualidade/{name}": n for name, n in checked.items()}
    versions.publish(base, version, tables, rows, dropped)
    versions.collect_old(base, keep)
    release.register_release(spark, base, database)
    return written


def land(spark: SparkSession, delivery: str, base: str) -> dict[int, int]:
    """Land DELIVERY/ano=YYYY below BASE/bronze byte by byte; files landed per edition that was not there."""
    done = {}
    for edition in sorted(landed_editions(spark, delivery)):
        landed = land_delivery(spark, edition_path(delivery, edition), f"{base}/bronze", edition)
        if landed is not None:
            done[edition] = len(landed)
    return done


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("base")
    parser.add_argument("--mapping")
    parser.add_argument("--step", choices=("silver", "gold", "all"), default="all")
    parser.add_argument("--delivery", help="land these files first")
    parser.add_argument("--no-line-breaks", action="store_true", help="no answer holds a line break")
    parser.add_argument("--expected", help="JSON file: rows of each edition")
    parser.add_argument("--no-volume-gate", action="store_true")
    parser.add_argument("--database", help="register the layers as external tables")
    parser.add_argument("--keep", type=int, default=2, help="releases that stay readable")
    parser.add_argument("--quarantine", action="store_true", help="set rows aside that break a rule of the core layer")
    parser.add_argument("--editions", type=int, nargs="*", default=(), help="the only editions that changed")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("survey release").getOrCreate()
    if args.delivery:
        land(spark, args.delivery, args.base)
    expected = json.loads(store.read_text(args.expected)) if args.expected else {}
    for name, rows in run(spark, args.base, args.step, args.mapping, not args.no_volume_gate, not args.no_line_breaks,
                          {int(e): n for e, n in expected.items()}, args.database, args.keep, args.editions,
                          args.quarantine).items():
        print(f"{name}: {rows}")
    spark.stop()


if __name__ == "__main__":
    main()
