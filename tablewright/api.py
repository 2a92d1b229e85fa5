"""All stages and table functions under one name."""

from tablewright.operators.apply import (  # noqa: F401
    ColumnFunction, MultiColumnAdapter, UDFTransformer, get_value_at, to_vector,
)
from tablewright.operators.balance import ClassBalancer, ClassBalancerModel  # noqa: F401
from tablewright.operators.categorical import (  # noqa: F401
    IndexToValue, ValueIndexer, ValueIndexerModel, one_hot,
)
from tablewright.operators.cleaning import (  # noqa: F401
    CleanMissingData, CleanMissingDataModel, drop_missing,
)
from tablewright.operators.columns import (  # noqa: F401
    DropColumns, RenameColumn, Repartition, SelectColumns, union_copies,
)
from tablewright.operators.convert import DataConversion  # noqa: F401
from tablewright.operators.ensemble import EnsembleByKey  # noqa: F401
from tablewright.operators.featurize import (  # noqa: F401
    AssembleFeatures, AssembleFeaturesModel, Featurize, fast_vector_assemble,
)
from tablewright.operators.images import (  # noqa: F401
    ImageSetAugmenter, ImageTransformer, UnrollImage,
)
from tablewright.operators.instance import ComputePerInstanceStatistics  # noqa: F401
from tablewright.operators.metrics import ComputeModelStatistics  # noqa: F401
from tablewright.operators.profile import SummarizeData, summarize  # noqa: F401
from tablewright.operators.sampling import (  # noqa: F401
    PartitionSample, assign_partition, exact_sample, hash_sample, hash_split, head, k_fold,
    random_split,
)
from tablewright.operators.scoring import (  # noqa: F401
    BatchScorer, ImageFeaturizer, arg_max, dense_model,
)
from tablewright.operators.select_model import (  # noqa: F401
    BestModel, DiscreteHyperParam, DoubleRangeHyperParam, FindBestModel, FloatRangeHyperParam,
    GridSpace, HyperparamBuilder, IntRangeHyperParam, LongRangeHyperParam, RandomSpace,
    TuneHyperparameters, TuneHyperparametersModel, default_range,
)
from tablewright.operators.text import TextFeaturizer, TextFeaturizerModel  # noqa: F401
from tablewright.operators.text_replace import TextPreprocessor  # noqa: F401
from tablewright.operators.timing import Timer, TimerModel  # noqa: F401
from tablewright.operators.train import (  # noqa: F401
    TrainClassifier, TrainedClassifierModel, TrainedRegressorModel, TrainRegressor,
)
from tablewright.sources.binary import (  # noqa: F401
    read_binary_files, read_from_paths, stream_binary_files,
)
from tablewright.sources.export import export, to_vector_columns, to_vector_text  # noqa: F401
from tablewright.sources.images import (  # noqa: F401
    read_images, read_images_from_paths, stream_images,
)
from tablewright.sources.sinks import (  # noqa: F401
    json_payloads, json_rows, stream_json, write_files, write_json_batches,
)
from tablewright.sources.tables import (  # noqa: F401
    Cacher, CheckpointData, load_csv, load_table, persist_to_table,
)
from tablewright.streaming.stages import (  # noqa: F401
    apply_to_stream, memory_table, run_to_table, stream_table,
)
