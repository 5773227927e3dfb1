"""Authority vocabularies: which vocabulary an IRI belongs to, and whether an IRI is sound at all."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CURATED_HOST = "http://data.europeana.eu/"

# Vocabulary, and the addresses (without scheme) that its IRIs begin with.
VOCABULARIES: dict[str, tuple[str, ...]] = {
    "aat": ("vocab.getty.edu/aat",),
    "abr": ("data.cultureelerfgoed.nl/term/id/abr/",),
    "adamlink": ("adamlink.nl/person/", "adamlink.nl/geo/street/", "adamlink.nl/geo/building/"),
    "brinkman": ("data.bibliotheken.nl/id/thes/",),
    "chit": ("semantics.gr/authorities/ekt-item-types/",),
    "cht": ("data.cultureelerfgoed.nl/term/id/cht/",),
    "debias": ("data.europa.eu/c4p/data/", "rnd-2.eanadev.org/share/debias/vocabulary/"),
    "dismarc_format": ("purl.org/dismarc/ns/dmFormats/",),
    "dismarc_genres": ("purl.org/dismarc/ns/dmGenres/",),
    "eagle": ("www.eagle-network.eu/voc/material/lod/",),
    "europeana_fashion": ("thesaurus.europeanafashion.eu/thesaurus/",),
    "europeana_sounds": ("data.europeana.eu/concept/soundgenres/",),
    "europeana_ww1": ("data.europeana.eu/concept/loc",),
    "eurovoc": ("eurovoc.europa.eu/",),
    "fghc": ("semantics.gr/authorities/searchculture-persons/",),
    "fit": ("semantics.gr/authorities/craft-item-types/",),
    "geonames": ("sws.geonames.org/",),
    "ghp": ("semantics.gr/authorities/historical-periods/",),
    "gnd": ("d-nb.info/gnd",),
    "gtaa": ("data.beeldengeluid.nl/gtaa/",),
    "homosaurus": ("data.ihlia.nl/homosaurus/",),
    "iconclass": ("iconclass.org/",),
    "ied": ("data.indischherinneringscentrum.nl/ied/",),
    "imj": ("www.imj.org.il/imagine/thesaurus/objects",),
    "kulturnav": ("kulturnav.org/",),
    "kv": ("data.cultureelerfgoed.nl/koloniaalverleden/",),
    "lcnaf": ("id.loc.gov/authorities/names/",),
    "lcsh": ("id.loc.gov/authorities/subjects/",),
    "mimo": ("www.mimo-db.eu/InstrumentMaker", "www.mimo-db.eu/InstrumentsKeywords", "www.mimo-db.eu/HornbostelAndSachs"),
    "muziekschatten": ("data.muziekschatten.nl/som/",),
    "obg": ("obg.vocnet.org/",),
    "partage_plus": ("partage.vocnet.org/",),
    "tgn": ("vocab.getty.edu/tgn/",),
    "thp": ("terms.personsincontext.org/ThesaurusHistorischePersoonsgegevens/",),
    "tt": ("semantics.gr/authorities/thematic_tags/",),
    "udc": ("udcdata.info/rdf",),
    "ulan": ("vocab.getty.edu/ulan",),
    "unesco": ("vocabularies.unesco.org/thesaurus/",),
    "unesco_t": ("semantics.gr/authorities/ekt-unesco/",),
    "viaf": ("viaf.org/viaf/",),
    "westerbork": ("digitaalerfgoed.poolparty.biz/westerbork/",),
    "wikidata": ("www.wikidata.org/entity/",),
    "wo2b": ("data.niod.nl/WO2_biografieen/",),
    "wo2t": ("data.niod.nl/WO2_Thesaurus/",),
    "yso": ("www.yso.fi/onto/yso/",),
}


def vocabulary(iri: Column, table: dict[str, tuple[str, ...]] = VOCABULARIES) -> Column:
    """Name of the vocabulary whose address, http or https, the IRI begins with; null for none.

    The host picks the few addresses that are compared, so that an IRI is held against
    those of its host and not against the whole table.
    """
    by_host: dict[str, list[tuple[str, str]]] = {}
    for name, addresses in table.items():
        for address in addresses:
            by_host.setdefault(address.split("/")[0], []).append((address, name))
    entries = [x for host, found in sorted(by_host.items()) for x in (F.lit(host), F.array(*[F.struct(F.lit(a).alias("address"), F.lit(n).alias("name")) for a, n in found]))]
    bare = F.regexp_extract(iri, r"^https?://(.*)$", 1)
    found = F.element_at(F.create_map(*entries), F.split_part(bare, F.lit("/"), F.lit(1)))
    return F.get(F.filter(found, lambda x: F.startswith(bare, x["address"])), F.lit(0))["name"]


def is_known(iri: Column, table: dict[str, tuple[str, ...]] = VOCABULARIES) -> Column:
    return vocabulary(iri, table).isNotNull()


def is_well_formed(iri: Column) -> Column:
    """An absolute http(s) IRI with a path, without white space or unfilled $1 placeholders; false for null and empty."""
    sound = iri.rlike(r"^https?://[A-Za-z0-9.-]+/") & ~iri.rlike(r"\s") & ~iri.rlike(r"\$[0-9]")
    return F.coalesce(sound, F.lit(False))


def host_of(iri: Column) -> Column:
    """Host of an http(s) IRI, '' where there is none."""
    return F.regexp_extract(iri, "https?://([^/]+)", 1)


def link_fault(iri: Column, known: Column) -> Column:
    """Class of a link: well-formed and known or not, else the first fault that it shows."""
    return (
        F.when(is_well_formed(iri) & known, "well-formed + known")
        .when(is_well_formed(iri), "well-formed + outside")
        .when(iri.isNull() | (iri == ""), "malformed: empty")
        .when(iri.rlike(r"\s"), "malformed: whitespace")
        .when(iri.rlike(r"\$[0-9]"), "malformed: template_artefact")
        .when(iri.startswith("file://"), "malformed: non_lod_scheme (file://)")
        .when(~iri.rlike("^https?://"), "malformed: non_lod_scheme (other)")
        .otherwise("malformed: bad_authority")
    )
