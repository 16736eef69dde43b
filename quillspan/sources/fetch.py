"""Articles and lookups from services, and files to download; the calls are given by the user."""

from __future__ import annotations

from collections.abc import Callable

from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.providers import lookup, with_retries

# Public services and what is asked of them.
ARTICLES = "https://www.ncbi.nlm.nih.gov/research/bionlp/RESTful/pmcoa.cgi/BioC_xml/"
COMPOUNDS = "https://pubchem.ncbi.nlm.nih.gov/rest/pug/compound/"
TAXA = "https://api.ncbi.nlm.nih.gov/datasets/v2/taxonomy/taxon/"
NATURAL_PRODUCTS = "https://npclassifier.gnps2.org/classify?smiles="


def quoted(x: Column) -> Column:
    """x for use in an address: all but letters, digits and -._~/ as UTF-8 bytes in hex."""
    out = F.url_encode(x)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        out = F.replace(out, F.lit(found), F.lit(wanted))
    return out


def article_address(pmcid: Column) -> Column:
    return F.concat(F.lit(ARTICLES), quoted(pmcid), F.lit("/ascii"))


def compound_ids_address(name: Column) -> Column:
    """The ids of a compound's name."""
    return F.concat(F.lit(COMPOUNDS + "name/"), quoted(name), F.lit("/cids/JSON"))


def compound_properties_address(cid: Column) -> Column:
    """SMILES and InChIKey of an id."""
    return F.concat(F.lit(COMPOUNDS + "cid/"), cid.cast("string"), F.lit("/property/IsomericSMILES,InChIKey/JSON"))


def taxon_address(name: Column) -> Column:
    return F.concat(F.lit(TAXA), quoted(name))


def natural_product_address(smiles: Column) -> Column:
    return F.concat(F.lit(NATURAL_PRODUCTS), quoted(smiles))


def fetch_articles(ids: DataFrame, call: Callable[[str], str | None], attempts: int = 5, at_once: int | None = None) -> DataFrame:
    """id and xml of each distinct id that call() has a text for; ids without one have a null, not an error.

    call may raise Busy with the wait that the service asks for; it is tried again then.
    """
    asked = with_retries(call, attempts)
    return lookup(ids, "id", lambda keys: [{"id": k, "xml": asked(k)} for k in keys], "id string, xml string", at_once=at_once)


def fetch_or_list(ids: DataFrame, call: Callable[[str], str | None], attempts: int = 5, at_once: int | None = None) -> DataFrame:
    """id, xml and error: as fetch_articles(), but an id that fails after all attempts is listed with its error."""
    asked = with_retries(call, attempts)

    def each(keys: list) -> list[dict]:
        out = []
        for k in keys:
            try:
                xml = asked(k)
                out.append({"id": k, "xml": xml, "error": None if xml is not None else "no text"})
            except Exception as e:  # whatever a call raises is what the list is for
                out.append({"id": k, "xml": None, "error": f"{type(e).__name__}: {e}"})
        return out

    return lookup(ids, "id", each, "id string, xml string, error string", at_once=at_once)


def download_missing(files: dict[str, str], folder: str, get: Callable[[str], bytes], sizes: dict[str, int] | None = None) -> list[str]:
    """Fetches files (name: address) that folder doesn't have, or has in another size than expected or empty.

    Returns the names that were fetched.  A file is written whole and then named; one of a wrong size is an error.
    """
    store, path = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
    store.create_dir(path, recursive=True)
    fetched = []
    for name, address in files.items():
        wanted = (sizes or {}).get(name)
        there = store.get_file_info(f"{path}/{name}")
        if there.type == fs.FileType.File and there.size and wanted in (None, there.size):
            continue
        raw = get(address)
        if not raw or (wanted is not None and len(raw) != wanted):
            raise OSError(f"{name}: {len(raw)} bytes, not {wanted or 'some'}")
        with store.open_output_stream(f"{path}/_{name}.part") as f:
            f.write(raw)
        if there.type == fs.FileType.File:
            store.delete_file(f"{path}/{name}")
        store.move(f"{path}/_{name}.part", f"{path}/{name}")
        fetched.append(name)
    return fetched
