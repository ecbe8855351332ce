"""``python -m layercake <bronze|silver|gold|all> --date D [--base URI] ...``"""

from layercake.plans.runner import main

raise SystemExit(main())
