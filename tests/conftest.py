import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerline.session import checkpoint_dir, get_session

    s = get_session("local[4]", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt"))})
    checkpoint_dir(s)
    yield s
    s.stop()
