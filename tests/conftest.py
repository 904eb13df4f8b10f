import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tcelake.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=4)
    yield s


SAMPLE_XML = """<tce>
  <schemaVersion>1.0</schemaVersion><dateUnit>weeks</dateUnit><baselineYear>1999</baselineYear>
  <patient><patientAlias>P-1</patientAlias><CD4NadirBeforeTCE>150</CD4NadirBeforeTCE></patient>
  <baselineRNA><logLoad>4.5</logLoad><rawLoad>31000</rawLoad><relativeDate>0</relativeDate><vLoadMatch>=</vLoadMatch></baselineRNA>
  <followupRNA><logLoad>2.1</logLoad><relativeDate>12</relativeDate></followupRNA>
  <followupRNA><logLoad>3.0</logLoad><relativeDate>24</relativeDate></followupRNA>
  <baselineCD4><count>200</count><relativeDate>-1</relativeDate></baselineCD4>
  <pastCD4><count>180</count><relativeDate>-60</relativeDate></pastCD4>
  <baselineIsolate><gene>RT</gene><subtype>B</subtype><relativeDate>-2</relativeDate><aaStart>1</aaStart><aaStop>240</aaStop>
    <aaMutation><position>41</position><aminoAcid>L</aminoAcid></aaMutation>
    <aaMutation><position>215</position><aminoAcid>Y</aminoAcid><mixtures>YF</mixtures></aaMutation></baselineIsolate>
  <pastIsolate><gene>PR</gene></pastIsolate>
  <pastRegimenTreatments><relativeStartDate>-100</relativeStartDate><relativeStopDate>0</relativeStopDate><duration>100</duration>
    <drug><drugCode>AAA</drugCode><drugClass>NRTI</drugClass></drug></pastRegimenTreatments>
  <baselineNewTreatment><relativeStartDate>0</relativeStartDate>
    <drug><drugCode>CCC</drugCode><drugClass>PI</drugClass></drug><drug><drugCode>BBB</drugCode><drugClass>NRTI</drugClass></drug></baselineNewTreatment>
</tce>
"""


@pytest.fixture()
def case_dir(tmp_path):
    """A folder of case files: the sample, edge cases, and files that must be ignored."""
    d = tmp_path / "cases"
    d.mkdir()
    files = {
        "1.xml": SAMPLE_XML,
        "truncated.xml": "<tce><baselineYear>1999</baselineYear><patient>",
        "notxml.xml": "this is not xml",
        "empty.xml": "",
        "emptyleaf.xml": "<tce><patient><patientAlias>E</patientAlias><CD4NadirBeforeTCE/></patient></tce>",
        "repeated.xml": "<tce><patient><patientAlias>first</patientAlias><patientAlias>second</patientAlias></patient>"
                        "<baselineYear>2001</baselineYear><baselineYear>2002</baselineYear></tce>",
        "emptyparent.xml": "<tce><patient/><patient><patientAlias>filled</patientAlias></patient></tce>",
        "blank.xml": "<tce><baselineRNA><logLoad>3.3</logLoad><rawLoad></rawLoad><relativeDate>1</relativeDate>"
                     "</baselineRNA><pastRNA><rawLoad>   </rawLoad></pastRNA></tce>",
        "emptyisolate.xml": "<tce><baselineIsolate/><baselineIsolate><gene>RT</gene></baselineIsolate></tce>",
        "nodrugs.xml": "<tce><baselineNewTreatment><relativeStartDate>0</relativeStartDate></baselineNewTreatment></tce>",
        "unknownclass.xml": "<tce><baselineNewTreatment><drug><drugCode>ZZZ</drugCode><drugClass>XX</drugClass></drug>"
                            "</baselineNewTreatment></tce>",
        "dupdrug.xml": "<tce><baselineNewTreatment><drug><drugCode>AAA</drugCode><drugClass>NRTI</drugClass></drug>"
                       "<drug><drugCode>AAA</drugCode><drugClass>NRTI</drugClass></drug></baselineNewTreatment></tce>",
        "twonodes.xml": "<tce><baselineNewTreatment><drug><drugCode>AAA</drugCode><drugClass>NRTI</drugClass></drug>"
                        "</baselineNewTreatment><baselineNewTreatment><drug><drugCode>DDD</drugCode>"
                        "<drugClass>INI</drugClass></drug></baselineNewTreatment></tce>",
        "unknownelem.xml": "<tce><extra>1</extra><baselineYear>2003</baselineYear></tce>",
        "wrapped.xml": "<tce><wrap><baselineCD4><count>5</count></baselineCD4><baselineIsolate><gene>RT</gene><set><aaMutation>"
                       "<position>41</position></aaMutation></set></baselineIsolate></wrap><baselineIsolate><gene>PR</gene>"
                       "</baselineIsolate><baselineNewTreatment><drug><drugCode>AAA</drugCode><drugClass>NRTI</drugClass></drug><set><drug><drugCode>BBB"
                       "</drugCode></drug></set></baselineNewTreatment></tce>",
        "cdata.xml": "<tce><dateUnit><![CDATA[<tce>weeks]]></dateUnit><baselineYear>2004</baselineYear></tce><?done now?>",
        "nocharset.xml": '<?xml version="1.0" encoding="x-none"?><tce><baselineYear>1999</baselineYear></tce>',
        "special.xml": "<tce><baselineYear>19<!-- c -->99</baselineYear><dateUnit><![CDATA[4.5]]></dateUnit>"
                       "<schemaVersion>a&amp;b</schemaVersion></tce>",
        "trailing.xml": "<tce><baselineYear>1999</baselineYear></tce><tce/>",
        "other.txt": "<tce/>",
    }
    for name, text in files.items():
        (d / name).write_text(text, encoding="utf-8")
    (d / "latin1.xml").write_bytes('<?xml version="1.0" encoding="ISO-8859-1"?>\n<tce><patient><patientAlias>José'
                                   '</patientAlias></patient></tce>'.encode("iso-8859-1"))
    (d / "cp1252.xml").write_bytes('<?xml version="1.0" encoding="windows-1252"?><tce><patient><patientAlias>Zoë €'
                                   '</patientAlias></patient></tce>'.encode("cp1252"))
    (d / "longdecl.xml").write_bytes(f'<?xml version="1.0" {" " * 300} encoding="ISO-8859-1"?><tce><patient><patientAlias>José'
                                     '</patientAlias></patient></tce>'.encode("iso-8859-1"))
    (d / "u8bom.xml").write_bytes(b"\xef\xbb\xbf<tce><baselineYear>1998</baselineYear></tce>")
    (d / "u16.xml").write_bytes('<?xml version="1.0" encoding="UTF-16"?><tce><baselineYear>2002</baselineYear>'
                                '</tce>'.encode("utf-16"))
    (d / "bad8.xml").write_bytes(b"<tce><baselineYear>19\xff\xfe99</baselineYear></tce>")   # invalid UTF-8
    (d / "sub").mkdir()
    (d / "sub" / "y.xml").write_text("<tce><baselineYear>1990</baselineYear></tce>")
    return str(d)
