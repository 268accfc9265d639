"""Explicit schemas: ids such as ``0704.0010`` must never be inferred as numbers."""

from pyspark.sql import types as T

DOC_VECTOR_DIMS = 256

_STRINGS = T.ArrayType(T.StringType())

DOCUMENT = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("source_id", T.StringType()),
        T.StructField("url", T.StringType(), False),
        T.StructField("publish_date", T.TimestampType()),
        T.StructField("modified_date", T.TimestampType()),
        T.StructField("stored_date", T.TimestampType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract", T.StringType()),
        T.StructField("authors", _STRINGS),
        T.StructField("categories", _STRINGS),
        T.StructField("keywords", _STRINGS),
        T.StructField("doc_vector", T.ArrayType(T.FloatType())),
    ]
)

# DDL form, for the nested raw records
ARXIV_RECORD = (
    "id string, categories string, versions array<struct<created:string>>, "
    "title string, abstract string, authors string"
)

_CONTRIBUTOR = (
    "struct<attributes:struct<bibliographic:boolean>,"
    "embeds:struct<users:struct<"
    "data:struct<attributes:struct<full_name:string>>,"
    "errors:array<struct<meta:struct<full_name:string>>>>>>"
)

OSF_RECORD = (
    "data struct<"
    "id:string,"
    "links:struct<html:string>,"
    "attributes:struct<title:string,description:string,date_published:string,"
    "date_created:string,date_modified:string,"
    "subjects:array<array<struct<id:string,text:string>>>>,"
    "relationships:struct<provider:struct<links:struct<related:struct<href:string>>>>,"
    f"embeds:struct<contributors:struct<data:array<{_CONTRIBUTOR}>>>>"
)

OSF_LIST_PAGE = (
    "data array<struct<links:struct<self:string>>>, "
    "meta struct<total:bigint,per_page:bigint>, "
    "links struct<next:string>"
)

OAI_RECORD = (
    "header struct<identifier:string,datestamp:string>, "
    "metadata struct<arXiv:struct<id:string,title:string>>"
)

OAI_TOKEN = "_VALUE string, _cursor bigint, _completeListSize bigint"
