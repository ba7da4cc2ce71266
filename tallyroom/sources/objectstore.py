"""Settings for S3-compatible object stores."""

from __future__ import annotations

import os

COMMITTERS = ("magic", "directory", "partitioned")

def object_store_conf(
    endpoint: str | None = None,
    access_variable: str = "ACCESSKEY",
    secret_variable: str = "SECRETKEY",
    path_style: bool = True,
    committer: str | None = "magic",
) -> dict[str, str]:
    """Session settings that make `s3a://` paths readable and writable.

    Such a store cannot rename: files written the usual way are copied once more when a job ends,
    and a failure meanwhile leaves half of them. `committer` names the way to commit instead, magic,
    directory or partitioned; it takes the cloud module that comes with Spark's Hadoop libraries.
    None keeps the usual way.

    Keys come from the environment and never from the code; without them the settings leave
    authentication to the cluster.
    """
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
    }
    if committer is not None:
        if committer not in COMMITTERS:
            raise ValueError(f"committer must be one of {', '.join(COMMITTERS)}")
        conf |= {
            "spark.hadoop.fs.s3a.committer.name": committer,
            "spark.hadoop.fs.s3a.committer.magic.enabled": str(committer == "magic").lower(),
            "spark.hadoop.mapreduce.outputcommitter.factory.scheme.s3a": (
                "org.apache.hadoop.fs.s3a.commit.S3ACommitterFactory"
            ),
            "spark.sql.sources.commitProtocolClass": (
                "org.apache.spark.internal.io.cloud.PathOutputCommitProtocol"
            ),
            "spark.sql.parquet.output.committer.class": (
                "org.apache.spark.internal.io.cloud.BindingParquetOutputCommitter"
            ),
        }
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    access, secret = os.environ.get(access_variable), os.environ.get(secret_variable)
    if bool(access) != bool(secret):
        raise ValueError(f"set both {access_variable} and {secret_variable}, or neither")
    if access and secret:
        conf["spark.hadoop.fs.s3a.aws.credentials.provider"] = (
            "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
        )
        conf["spark.hadoop.fs.s3a.access.key"] = access
        conf["spark.hadoop.fs.s3a.secret.key"] = secret
    return conf
