from ledgerlens.cli import main

raise SystemExit(main())
