"""Schemas of the data model, as DDL."""

from __future__ import annotations

HIT = (
    "id bigint, conceptrecid string, created string, metadata struct<title:string,resource_type:struct<type:string>,creators:array<struct<name:string>>,keywords:array<string>,license:struct<id:string>,access_right:string>, "
    "files array<struct<key:string,size:bigint,checksum:string,links:struct<self:string>>>, links struct<self_html:string>"
)
CANDIDATE = (
    "recid string, conceptrecid string, doi string, conceptdoi string, title string, creators array<string>, publication_date string, created string, keywords array<string>, license string, resource_type string, "
    "access_right string, zenodo_url string, files_total int, bytes_total bigint, files array<struct<key:string,size:bigint,ext:string,checksum:string,download:string>>, vasp_category string, vasp_rank int, "
    "vasp_files array<string>, primary_vasp_files array<string>, archives array<string>, processed_files array<string>, metadata_signals array<string>, signals array<string>, query string, retrieved_at string"
)
FRAME = (
    "frame_id string, calc_id string, source string, ionic_step int, n_atoms int, symbols array<string>, positions array<array<double>>, forces array<array<double>>, lattice array<double>, ref_energy double, "
    "ref_stress array<double>, e_free double, entropy_ts double, total_magnetization double, total_charge double, electronic_converged boolean, scf_de double"
)
REJECTION = ("stage string, id string, reason string, detail map<string,string>")
CALC = (
    "calc_id string, parser string, fallback_from string, frame_ids array<string>, shards array<string>, provenance struct<source:string,record_id:string,license:string,resource_type:string,title:string>, "
    "calc_parameters struct<run_type:string,functional:string,incar:map<string,string>,parameters:map<string,string>>, "
    "quality struct<electronic_converged:boolean,ionic_converged:boolean,n_frames:int,n_frames_scf_unconverged:int,n_frames_with_forces:int,n_frames_with_stress:int,n_frames_dropped_no_energy:int>, "
    "electronic struct<net_magnetization:double,net_charge:double,magnetization_source:string>, availability map<string,boolean>"
)
