"""IRIs used by the operators. All are fixed values of public vocabularies."""

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
DCAM = "http://purl.org/dc/dcam/"
PROV = "http://www.w3.org/ns/prov#"
VOID = "http://rdfs.org/ns/void#"

RDF_TYPE = RDF + "type"
RDF_PROPERTY = RDF + "Property"
RDF_LANG_STRING = RDF + "langString"
RDFS_CLASS = RDFS + "Class"
RDFS_LABEL = RDFS + "label"
RDFS_SUBCLASS = RDFS + "subClassOf"
RDFS_SUBPROPERTY = RDFS + "subPropertyOf"
RDFS_DOMAIN = RDFS + "domain"
RDFS_RANGE = RDFS + "range"
OWL_CLASS = OWL + "Class"
OWL_OBJECT_PROPERTY = OWL + "ObjectProperty"
OWL_SAME_AS = OWL + "sameAs"
OWL_INVERSE_OF = OWL + "inverseOf"
OWL_SYMMETRIC = OWL + "SymmetricProperty"
OWL_TRANSITIVE = OWL + "TransitiveProperty"
OWL_FUNCTIONAL = OWL + "FunctionalProperty"
OWL_INVERSE_FUNCTIONAL = OWL + "InverseFunctionalProperty"
OWL_EQUIVALENT_CLASS = OWL + "equivalentClass"
OWL_EQUIVALENT_PROPERTY = OWL + "equivalentProperty"
OWL_ON_PROPERTY = OWL + "onProperty"
OWL_HAS_VALUE = OWL + "hasValue"
OWL_SOME_VALUES = OWL + "someValuesFrom"
OWL_ALL_VALUES = OWL + "allValuesFrom"
DCAM_RANGE_INCLUDES = DCAM + "rangeIncludes"
DCAM_DOMAIN_INCLUDES = DCAM + "domainIncludes"
SKOS_RELATED = SKOS + "related"
PROV_DERIVED = PROV + "wasDerivedFrom"

XSD_STRING = XSD + "string"

# Predicates and objects of derived triples, as published by the lake.
WALK_MEMBER = "http://inrae.fr/propertySubGraphElementOf"
VOID_EXT_RANGE = "http://inrae.fr/voidext/range"
VOID_EXT_DOMAIN = "http://inrae.fr/voidext/domain"
VOID_SOURCE = "http://stats.lod2.eu/rdf/void/?source="

# The datatypes averaged per property.
NUMERIC_DATATYPES = [XSD + name for name in ("int", "integer", "short", "decimal", "float", "double")]

# Numeric and temporal datatypes of XML Schema, used to order literals by value.
ALL_NUMERIC_DATATYPES = [
    XSD + name
    for name in (
        "decimal", "integer", "nonPositiveInteger", "negativeInteger", "long", "int", "short", "byte",
        "nonNegativeInteger", "unsignedLong", "unsignedInt", "unsignedShort", "unsignedByte",
        "positiveInteger", "float", "double",
    )
]
TEMPORAL_DATATYPES = [XSD + "dateTime", XSD + "date"]

# Graph formats accepted as RDF by the ingestion, plus the short names for the line formats.
RDF_FORMATS = [
    "TURTLE", "TTL", "NTRIPLES", "NT", "RDFXML", "N3", "JSONLD", "RDFJSON", "NQUADS", "NQ", "TRIG",
    "TRIGSTAR", "TRIX", "TURTLESTAR", "BINARY", "HDT", "NDJSONLD", "RDFA",
]
