"""Registry of raw tables: where their columns come from in the graph, and their Spark schemas.

Column names: k_ is a key, v_ a property as it stands, x_ something derived.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Namespaces of the data model.
NAMESPACES = {
    "cc": "http://creativecommons.org/ns#",
    "dc": "http://purl.org/dc/elements/1.1/",
    "dcterms": "http://purl.org/dc/terms/",
    "doap": "http://usefulinc.com/ns/doap#",
    "dqv": "http://www.w3.org/ns/dqv#",
    "ebucore": "http://www.ebu.ch/metadata/ontologies/ebucore/ebucore#",
    "edm": "http://www.europeana.eu/schemas/edm/",
    "foaf": "http://xmlns.com/foaf/0.1/",
    "oa": "http://www.w3.org/ns/oa#",
    "odrl": "http://www.w3.org/ns/odrl/2/",
    "ore": "http://www.openarchives.org/ore/terms/",
    "owl": "http://www.w3.org/2002/07/owl#",
    "rdaGr2": "http://rdvocab.info/ElementsGr2/",
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "schema": "http://schema.org/",
    "skos": "http://www.w3.org/2004/02/skos/core#",
    "svcs": "http://rdfs.org/sioc/services#",
    "wgs84": "http://www.w3.org/2003/01/geo/wgs84_pos#",
}


def expand(curie: str) -> str:
    prefix, _, name = curie.partition(":")
    return NAMESPACES[prefix] + name


def compact(uri: str) -> str:
    """The shortest form prefix:name, or the URI itself."""
    best = max(((ns, p) for p, ns in NAMESPACES.items() if uri.startswith(ns)), default=None)
    return f"{best[1]}:{uri[len(best[0]):]}" if best else uri


def column_of(curie: str) -> str:
    return "v_" + curie.replace(":", "_")


@dataclass(frozen=True)
class ValuesTable:
    """One row per subject: required patterns bind the subject (and its object), optional properties add columns."""

    name: str
    rdf_class: str | None = None
    about: str | None = None  # property whose object is the item the row belongs to
    about_column: str = "k_iri_cho"
    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    labelled: bool = False  # one row per skos:prefLabel, with its language


@dataclass(frozen=True)
class LinksTable:
    """One row per value of any of the properties: (k_iri, x_property, x_value, x_value_is_iri, x_value_lang)."""

    name: str
    rdf_class: str | None = None
    subject_of: str | None = None
    properties: tuple[str, ...] = field(default=())


def _t(text: str) -> tuple[str, ...]:
    return tuple(text.split())


VALUES = {
    t.name: t
    for t in (
        ValuesTable("values_edm_ProvidedCHO", rdf_class="edm:ProvidedCHO"),
        ValuesTable("values_ore_Proxy", about="ore:proxyFor", optional=_t("edm:currentLocation edm:europeanaProxy edm:isRepresentationOf edm:type ore:proxyIn")),
        ValuesTable("values_ore_Aggregation", about="edm:aggregatedCHO", required=_t("edm:dataProvider"), optional=_t("dcterms:created dcterms:modified edm:isShownAt edm:isShownBy edm:object edm:provider edm:rights edm:ugc")),
        ValuesTable("values_edm_EuropeanaAggregation", rdf_class="edm:EuropeanaAggregation", about="edm:aggregatedCHO", optional=_t("edm:completeness edm:country edm:datasetName edm:landingPage edm:language edm:preview"), numbers=_t("edm:completeness")),
        ValuesTable("values_edm_Agent", rdf_class="edm:Agent", labelled=True, optional=_t("edm:begin edm:end rdaGr2:dateOfBirth rdaGr2:dateOfDeath rdaGr2:dateOfEstablishment rdaGr2:dateOfTermination rdaGr2:gender")),
        ValuesTable("values_edm_Place", rdf_class="edm:Place", labelled=True, optional=_t("edm:isNextInSequence wgs84:alt wgs84:lat wgs84:long")),
        ValuesTable("values_skos_Concept", rdf_class="skos:Concept", labelled=True),
        ValuesTable("values_edm_TimeSpan", rdf_class="edm:TimeSpan", labelled=True, optional=_t("edm:begin edm:end edm:isNextInSequence skos:notation")),
        ValuesTable("values_foaf_Organization", rdf_class="foaf:Organization", labelled=True, optional=_t("edm:acronym edm:country edm:europeanaRole")),
        ValuesTable("values_cc_License", rdf_class="cc:License", optional=_t("cc:deprecatedOn odrl:inheritFrom")),
        ValuesTable("values_edm_PersistentIdentifier", rdf_class="edm:PersistentIdentifier", optional=_t("dcterms:created dc:creator edm:hasPolicy rdf:value skos:inScheme")),
        ValuesTable("values_edm_PersistentIdentifierScheme", rdf_class="edm:PersistentIdentifierScheme"),
    )
}

WEB_RESOURCE = ValuesTable(
    "values_edm_WebResource",
    optional=_t("ebucore:audioChannelNumber ebucore:bitRate ebucore:duration ebucore:fileByteSize ebucore:frameRate ebucore:hasMimeType ebucore:height ebucore:orientation ebucore:sampleRate ebucore:sampleSize ebucore:width edm:codecName edm:hasColorSpace edm:isNextInSequence edm:pointCount edm:polygonCount edm:preview edm:rights edm:spatialResolution edm:type edm:vertexCount rdf:type schema:digitalSourceType"),
    numbers=_t("ebucore:audioChannelNumber ebucore:bitRate ebucore:fileByteSize ebucore:height ebucore:sampleRate ebucore:sampleSize ebucore:width edm:pointCount edm:polygonCount edm:spatialResolution edm:vertexCount"),
    doubles=_t("ebucore:frameRate"),
)

LINKS = {
    t.name: t
    for t in (
        LinksTable("links_ore_Proxy", subject_of="ore:proxyFor", properties=_t("dc:contributor dc:coverage dc:creator dc:date dc:description dc:format dc:identifier dc:language dc:publisher dc:relation dc:rights dc:source dc:subject dc:title dc:type dcterms:alternative dcterms:conformsTo dcterms:created dcterms:extent dcterms:hasFormat dcterms:hasPart dcterms:hasVersion dcterms:isFormatOf dcterms:isPartOf dcterms:isReferencedBy dcterms:isReplacedBy dcterms:isRequiredBy dcterms:issued dcterms:isVersionOf dcterms:medium dcterms:provenance dcterms:references dcterms:replaces dcterms:requires dcterms:spatial dcterms:tableOfContents dcterms:temporal edm:hasMet edm:hasType edm:incorporates edm:isDerivativeOf edm:isNextInSequence edm:isRelatedTo edm:isSimilarTo edm:isSuccessorOf edm:realizes edm:userTag edm:year ore:lineage owl:sameAs")),
        LinksTable("links_ore_Aggregation", subject_of="edm:aggregatedCHO", properties=_t("dc:rights dqv:hasQualityAnnotation edm:hasView edm:intermediateProvider")),
        LinksTable("links_edm_WebResource", rdf_class="edm:WebResource", properties=_t("dc:creator dc:description dc:format dc:language dc:rights dc:source dc:title dc:type dcterms:conformsTo dcterms:created dcterms:extent dcterms:hasPart dcterms:isFormatOf dcterms:isPartOf dcterms:isReferencedBy dcterms:issued dcterms:temporal edm:componentColor edm:intendedUsage owl:sameAs svcs:has_service")),
        LinksTable("links_edm_Agent", rdf_class="edm:Agent", properties=_t("dc:date dc:identifier dcterms:hasPart dcterms:isPartOf edm:hasMet edm:isRelatedTo foaf:name owl:sameAs rdaGr2:biographicalInformation rdaGr2:placeOfBirth rdaGr2:placeOfDeath rdaGr2:professionOrOccupation skos:altLabel skos:hiddenLabel skos:note")),
        LinksTable("links_edm_Place", rdf_class="edm:Place", properties=_t("dcterms:hasPart dcterms:isPartOf owl:sameAs skos:altLabel skos:hiddenLabel skos:note")),
        LinksTable("links_skos_Concept", rdf_class="skos:Concept", properties=_t("owl:sameAs skos:altLabel skos:broadMatch skos:broader skos:closeMatch skos:exactMatch skos:hiddenLabel skos:inScheme skos:narrowMatch skos:narrower skos:notation skos:note skos:related skos:relatedMatch")),
        LinksTable("links_edm_TimeSpan", rdf_class="edm:TimeSpan", properties=_t("dcterms:hasPart dcterms:isPartOf owl:sameAs skos:altLabel skos:hiddenLabel skos:note")),
        LinksTable("links_foaf_Organization", rdf_class="foaf:Organization", properties=_t("edm:heritageDomain edm:language foaf:logo owl:sameAs")),
        LinksTable("links_svcs_Service", rdf_class="svcs:Service", properties=_t("dcterms:conformsTo doap:implements")),
        LinksTable("links_edm_PersistentIdentifier", rdf_class="edm:PersistentIdentifier", properties=_t("edm:equivalentPID edm:hasURL edm:replacesPID skos:notation")),
        LinksTable("links_edm_PersistentIdentifierScheme", rdf_class="edm:PersistentIdentifierScheme", properties=_t("dcterms:title")),
    )
}

ENTITY_CLASSES = ("edm_Agent", "edm_Place", "skos_Concept", "edm_TimeSpan")
LINK_SCHEMA = T.StructType([T.StructField("k_iri", T.StringType()), T.StructField("x_property", T.StringType()), T.StructField("x_value", T.StringType()), T.StructField("x_value_is_iri", T.BooleanType()), T.StructField("x_value_lang", T.StringType())])


def schema_of(table: ValuesTable) -> T.StructType:
    """Spark schema of a values table, columns in alphabetical order."""
    kinds: dict[str, T.DataType] = {"k_iri": T.StringType()}
    if table.about or table is WEB_RESOURCE:
        kinds[table.about_column] = T.StringType()
    if table.about == "ore:proxyFor":
        kinds["v_ore_proxyFor"] = T.StringType()
    for p in (*table.required, *table.optional):
        kinds[column_of(p)] = T.LongType() if p in table.numbers else T.DoubleType() if p in table.doubles else T.StringType()
    if table.labelled:
        kinds |= {"v_skos_prefLabel": T.StringType(), "x_prefLabel_lang": T.StringType()}
    return T.StructType([T.StructField(n, kinds[n]) for n in sorted(kinds)])


EXTRA_SCHEMAS = {
    "values_svcs_Service": "k_iri string, k_iri_webresource string",
    "values_publishing_tier": "k_iri string, x_content_tier_uri string, x_metadata_tier_uri string",
}


def raw_schemas() -> dict[str, T.StructType]:
    out = {n: schema_of(t) for n, t in VALUES.items()} | {"values_edm_WebResource": schema_of(WEB_RESOURCE)}
    out |= {n: T.StructType.fromDDL(s) for n, s in EXTRA_SCHEMAS.items()}
    return out | {n: LINK_SCHEMA for n in LINKS}
